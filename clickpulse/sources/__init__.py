"""Readers: delimited text, tables, databases and click streams."""
