"""Column expressions: text to values, dates, ratios, labels, header names."""
