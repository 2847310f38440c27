"""Column expressions: scoring rules, record checks and row hashes."""
