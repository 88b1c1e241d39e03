"""Queries over the test tables, composed of operators, functions and sources."""
