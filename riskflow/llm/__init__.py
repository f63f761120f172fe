"""Operators that prepare text collections: dedup, scoring, extraction, tokens, packing."""
