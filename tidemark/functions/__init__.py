"""Column expressions: envelope parsing and typed conversion."""
