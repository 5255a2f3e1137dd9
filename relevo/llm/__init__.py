"""Operators of a training-data pipeline: scoring, deduplication, mixing,
tokenising, language and toxicity labels, fingerprints.

Each module holds one operator with its own general interface; ``queries``
registers the thin ``opN_*`` queries.  Nothing else in the package imports
this one.
"""
