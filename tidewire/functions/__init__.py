"""Column expressions: text predicates, constraints, JSON codec, sentences."""
