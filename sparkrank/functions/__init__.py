"""Column expressions: text cleaning, vectors, splitting."""
