"""Column expressions: documents, moments and money."""
