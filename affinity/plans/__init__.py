"""Registered queries (Spark plans) and their DuckDB oracle SQL."""
