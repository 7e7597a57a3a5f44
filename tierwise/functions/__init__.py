"""Column expressions: cleaning, dates, keys and rounded measures."""
