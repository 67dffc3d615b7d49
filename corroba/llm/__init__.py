"""Operators for training-data pipelines: scoring, deduplication, filtering, redaction, sharding, packing.

Nothing outside this subpackage imports it. Each operator lives in its own module with a
general interface; ``queries`` binds them to the tables of a data folder.
"""
