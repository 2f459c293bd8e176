"""Column expressions: arithmetic and date helpers, and the trip quality rules."""
