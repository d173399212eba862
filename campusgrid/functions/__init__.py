"""Column expressions: text, numbers and classifications."""
