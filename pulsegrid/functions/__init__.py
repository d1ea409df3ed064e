"""Column-level functions: casts, scalars and text handling."""
