"""Clickstream and ad-click analytics as PySpark DataFrame operators."""
