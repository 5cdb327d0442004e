"""Composed jobs: the query catalog and incremental update jobs."""
