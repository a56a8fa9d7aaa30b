"""Column expressions: text measures, tokens, readability, rounding."""
