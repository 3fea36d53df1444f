"""Operators for preparing training data: text statistics, near duplicates, mixing, packing, scoring."""
