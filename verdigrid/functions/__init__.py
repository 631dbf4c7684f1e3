"""Column expressions with fixed semantics."""
