"""Column expressions: text, dates, verdicts."""
