"""End-to-end plans (pipeline.py) and the registry of named queries with their DuckDB oracles."""
