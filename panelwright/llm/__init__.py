"""Operators for training-data corpora: extraction, mixing, tokens, search, duplicates, archives and models of text."""
