"""Column-to-column functions; every one is a built-in expression."""
