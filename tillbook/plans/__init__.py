"""Reports, quality checks and the verification run."""
