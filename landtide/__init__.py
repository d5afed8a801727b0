"""Landtide: land-change monitoring and analytics expressed as Spark plans."""
