"""Column expressions, type maps and small name helpers."""
