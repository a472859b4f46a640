"""Compositions: the medallion cycle, serving queries, the query catalogue."""
