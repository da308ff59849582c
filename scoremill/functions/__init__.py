"""Scalar helpers: dates, names, bands and cleaning predicates."""
