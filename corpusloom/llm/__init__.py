"""Operators of a training-data pipeline: extraction, language, near-duplicates, quality, lines, rules, shards, packing,
links and benchmark leaks.

Nothing else in the library imports this package. Importing ``corpusloom.llm.queries`` registers the queries.
"""
