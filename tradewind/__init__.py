"""Retail analytics warehouse written as Spark DataFrame jobs."""
