"""Column-level building blocks: casts, keys, bands, masks and variant paths."""
