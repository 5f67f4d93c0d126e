"""Reusable DataFrame operators: keys, windows, sets, quality reports."""
