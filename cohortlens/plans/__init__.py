"""Registered queries: operators bound to the available tables, each with its SQL meaning."""
