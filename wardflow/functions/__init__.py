"""Column expressions: text, dates, labels and scores."""
