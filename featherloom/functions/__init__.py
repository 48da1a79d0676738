"""Column expressions and the aggregate registry."""
