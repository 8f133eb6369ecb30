"""Column expressions and selection strings."""
