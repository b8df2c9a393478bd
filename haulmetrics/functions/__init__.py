"""Column expressions: numbers, text, dates, hashing. No Python UDFs."""
