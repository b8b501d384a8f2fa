"""Named queries over the shared test tables, their DuckDB oracle SQL, and helpers to
inspect executed plans."""
