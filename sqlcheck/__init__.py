"""Independent SQL (DuckDB dialect) for every registered query, used as the value oracle."""
