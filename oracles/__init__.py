"""SQL that states the registered queries for DuckDB."""
