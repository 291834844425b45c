"""Retail transaction streams on Spark: decode, flatten, enrich, archive, total."""
