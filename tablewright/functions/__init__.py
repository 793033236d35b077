"""Column-level helpers: declared types, literals, key expressions."""
