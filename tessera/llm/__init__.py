"""Operators for large training-text corpora (quality, dedup, decontamination, archives, tokens)."""
