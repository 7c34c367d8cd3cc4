"""Dimensional ETL and ELT on Spark: stage, conform, key, merge, audit."""
