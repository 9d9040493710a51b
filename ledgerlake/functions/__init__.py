"""Column expressions: quality rules and derived columns."""
