"""Curate chat training rows and score model answers as Spark DataFrame jobs."""

__version__ = "0.1.0"
