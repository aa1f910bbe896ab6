"""Stored tables: append, publish a new version, replace partitions."""
