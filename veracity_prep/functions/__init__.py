"""Column expressions: text, labels, scores, URLs and JSON fields."""
