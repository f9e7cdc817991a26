"""Batch and incremental analytics over incident feeds, written as Spark jobs."""
