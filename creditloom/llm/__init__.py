"""Operators for building training corpora: labels, counts, rules, search, duplicates, mixing, packing."""
