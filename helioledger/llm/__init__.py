"""Operators for preparing training data: language, quality, mixing, shards, search, duplicates, pages, secrets, tokens."""
