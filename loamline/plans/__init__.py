"""Registered queries, their DuckDB twins, and the feature query as SQL."""
