"""Column expressions and the two vectorised statistics functions."""
