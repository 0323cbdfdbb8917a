"""Column functions: text, dates, numbers and metrics."""
