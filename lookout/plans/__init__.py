"""Pipelines made of the operators, and the queries that run them over the test tables."""
