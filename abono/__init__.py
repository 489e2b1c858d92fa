"""Subscription analytics as PySpark DataFrame operators and jobs."""
