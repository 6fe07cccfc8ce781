"""Whole runs put together from operators, sources and tables."""
