"""Strandline: Spark-first transforms for longitudinal study data."""
