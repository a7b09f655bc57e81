"""Column expressions: paths, bound texts, messages and times."""
