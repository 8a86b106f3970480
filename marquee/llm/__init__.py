"""Operators of a training-data pipeline: tokens, language, URLs, toxicity, benchmark overlap, fingerprints,
chat formatting, near duplicates and licences. Nothing else in the library imports this package."""
