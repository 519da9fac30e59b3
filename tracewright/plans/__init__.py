"""Query catalogue: named plans over the given tables and their DuckDB oracles."""
