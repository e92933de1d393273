"""Listening-history analytics written as Spark DataFrame jobs."""
