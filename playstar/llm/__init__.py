"""Operators on training text, vectors and urls: filters, near duplicates, tokens, packing, search."""
