"""Column expressions (money, names)."""
