"""Programs for spark-submit."""
