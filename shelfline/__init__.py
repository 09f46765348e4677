"""Marketplace listing analytics as Spark DataFrame jobs."""
