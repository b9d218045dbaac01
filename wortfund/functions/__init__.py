"""Column expressions: markup cleaning, entity decoding, tokens."""
