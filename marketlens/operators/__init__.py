"""Reusable DataFrame -> DataFrame operators the report queries are built from."""
