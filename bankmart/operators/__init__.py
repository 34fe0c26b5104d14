"""Relational and business operators, each a DataFrame → DataFrame function."""
