"""The registered queries, their SQL checks and the inputs derived from the given tables."""
