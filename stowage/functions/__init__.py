"""Column-level functions: types, coercion, names and shards."""
