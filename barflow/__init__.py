"""barflow: market-style bar pipelines as PySpark DataFrame programs."""
