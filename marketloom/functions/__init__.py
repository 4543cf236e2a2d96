"""Column expressions: parsing, text, money, dates and threshold buckets."""
