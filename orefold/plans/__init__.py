"""Whole runs from landing files to Gold tables."""
