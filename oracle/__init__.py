"""DuckDB oracle SQL for the registered queries (independent re-statements)."""
