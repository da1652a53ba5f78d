"""Audience and ad-log analytics as Spark DataFrame jobs."""
