"""Column expressions: text, hashing, statistics and vectors."""
