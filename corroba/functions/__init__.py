"""Column expressions: names, document ids, scores, similarity."""
