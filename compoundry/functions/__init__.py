"""Column functions. All are built-in expressions: no Python runs per row."""
