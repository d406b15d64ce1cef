"""Spark jobs over a national registry of healthcare providers."""
