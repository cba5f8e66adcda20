"""Retail sales preparation and reporting as PySpark DataFrame operators."""
