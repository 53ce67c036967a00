"""Operators for the preparation of training text, and the queries that apply them."""
