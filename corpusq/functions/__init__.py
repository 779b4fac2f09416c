"""Column expressions: text analysis, typed tokens, term weights."""
