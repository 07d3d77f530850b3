"""Column functions: each takes and returns Columns."""
