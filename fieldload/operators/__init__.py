"""Relational operators of the import, each a DataFrame -> DataFrame function."""
