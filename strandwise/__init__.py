"""Immune-repertoire and training-data analytics as Spark jobs."""
