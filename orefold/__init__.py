"""Layered (Bronze, Silver, Gold) analytics written as plain PySpark jobs."""

__version__ = "0.1.0"
