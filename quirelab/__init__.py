"""Spark-first engine for building and auditing digital editions of handwritten journals."""

__version__ = "0.1.0"
