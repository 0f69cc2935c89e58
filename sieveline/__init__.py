"""Retrieval analytics over text corpora, written as Spark DataFrame jobs."""

__version__ = "0.1.0"
