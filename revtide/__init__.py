"""Subscription revenue analytics as PySpark DataFrame operators."""
