"""Operators of a training-data pipeline: near and exact duplicates, page text, packing, licences, toxicity, language
models, benchmark leaks, addresses and languages. Nothing else in the library imports this package."""
