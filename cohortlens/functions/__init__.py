"""Column expressions: dates, recodes, fixed code lists."""
