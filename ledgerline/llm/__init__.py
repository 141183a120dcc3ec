"""Operators for preparing training text: filters, near duplicates, tokens, files."""
