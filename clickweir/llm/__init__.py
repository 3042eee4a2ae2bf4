"""Operators for large text corpora: quality, secrets, archives, near copies, mixing, tokens."""
