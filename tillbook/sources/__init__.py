"""Where raw events come from."""
