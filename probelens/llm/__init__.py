"""Operators of a training-data pipeline, one module per operator.

Nothing outside this package imports it. ``catalog`` registers the queries,
``sql`` holds their DuckDB statements.
"""
