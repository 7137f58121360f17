"""Operators for preparing training data: tokens, quality, languages, duplicates, mixing, sharding, search."""
