"""Column expressions and column-list helpers."""
