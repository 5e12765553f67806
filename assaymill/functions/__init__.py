"""Column expressions and small Arrow helpers."""
