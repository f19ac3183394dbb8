"""Column expressions: text, labels, vectors, stemming."""
