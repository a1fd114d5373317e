"""Training-data operators: packing, near-duplicates, scoring, mixing, filters and extraction.

Nothing outside this subpackage imports it.
"""
