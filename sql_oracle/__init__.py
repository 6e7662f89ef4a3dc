"""DuckDB oracle statements for the correctness check (not used by the library)."""
