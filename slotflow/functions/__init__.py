"""Column functions: null-safe columns and exact sums, names and ids, date parts, nested data."""
