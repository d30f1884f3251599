"""Operational star-schema analytics on Spark."""
