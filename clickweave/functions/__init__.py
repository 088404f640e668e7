"""Column expressions without any table access."""
