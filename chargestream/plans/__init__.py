"""Whole jobs composed of the operators, and the queries that show each of them."""
