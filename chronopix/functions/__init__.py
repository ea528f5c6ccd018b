"""Column expressions and aggregate expressions."""
