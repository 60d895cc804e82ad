"""Column functions: built-in expressions only, no Python on the executors."""
