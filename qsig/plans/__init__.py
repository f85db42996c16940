"""Composed jobs (jobs.py), test-table adapters (adapters.py) and registered queries with
their DuckDB oracle SQL (catalog.py)."""
