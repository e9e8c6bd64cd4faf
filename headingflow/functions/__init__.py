"""Column expressions: text, values and ranked candidates."""
