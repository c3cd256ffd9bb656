"""Queries over the bout warehouse, with their SQL where SQL can say it."""
