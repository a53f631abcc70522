"""Whole flows made of the operators, and the queries over the sample tables."""
