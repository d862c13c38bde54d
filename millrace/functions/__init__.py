"""Column-valued functions: text, hashing, scoring and semantics."""
