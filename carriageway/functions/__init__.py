"""Column functions: no action, no Python on the executors."""
