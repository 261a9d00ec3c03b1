"""Column expressions: text, calendar, exact numbers, scores."""
