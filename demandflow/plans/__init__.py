"""End-to-end compositions, the query registry and its DuckDB oracle SQL."""
