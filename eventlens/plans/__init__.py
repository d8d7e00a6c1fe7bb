"""Named queries over the driver's tables, their DuckDB oracles, plan checks."""
