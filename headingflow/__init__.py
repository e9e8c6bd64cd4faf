"""Heading assignment for institutional questions, as Spark DataFrame jobs."""
