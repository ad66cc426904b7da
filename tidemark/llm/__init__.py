"""Operators on training-data tables: one module per operator, queries in ``queries.py``."""
