"""Whole jobs: building the tables, and the query catalogue with its SQL twins."""
