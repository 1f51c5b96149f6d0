"""Whole jobs, the registry of named queries and the SQL they are checked against."""
