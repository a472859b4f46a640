"""Column expressions: bands, scores, statistics.  No UDFs."""
