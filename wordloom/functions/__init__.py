"""Column expressions: text cleaning, JSON records, vectors."""
