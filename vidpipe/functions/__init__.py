"""Column functions: text parsers, tolerant values, urls."""
