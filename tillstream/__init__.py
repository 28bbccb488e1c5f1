"""Retail real-time analytics as PySpark jobs: change capture, dimensions, facts, wide table, reports."""
