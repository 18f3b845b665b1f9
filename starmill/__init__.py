"""Builds a checked retail star schema, and its measures, as Spark DataFrame jobs."""
