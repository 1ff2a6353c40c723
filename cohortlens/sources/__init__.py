"""Typed readers, header cleaning, writers."""
