"""Column expressions: text, numbers, diversity and geometry."""
