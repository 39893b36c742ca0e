"""Column-level functions: built-in expressions only."""
