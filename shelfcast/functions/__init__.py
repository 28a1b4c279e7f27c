"""Column functions. Each takes columns (or column names) and returns one column."""
