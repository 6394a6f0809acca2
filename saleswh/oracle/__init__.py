"""Independent DuckDB oracle SQL for the correctness gate."""
