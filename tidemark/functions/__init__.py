"""Column expressions: times, text, nested values, numbers."""
