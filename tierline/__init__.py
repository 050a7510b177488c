"""Layered, incremental lake tables on Spark: raw -> clean -> counts."""
