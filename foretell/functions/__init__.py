"""Column functions: built-in expressions only, no Python in the row path."""
