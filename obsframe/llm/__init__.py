"""Operators for large text corpora: tokens, duplicates, packing, search, archives, privacy, toxicity."""
