"""Column and row functions: money, time, payload coding."""
