"""Operators for text corpora and pairwise evidence; nothing outside this folder imports them."""
