"""Cohort risk screening on Spark: clean, score, rank and evaluate large survey tables."""
