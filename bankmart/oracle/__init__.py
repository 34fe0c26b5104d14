"""DuckDB oracle SQL for every SQL-expressible query (correctness gate)."""
