"""Column functions, surrogate keys and lookups."""
