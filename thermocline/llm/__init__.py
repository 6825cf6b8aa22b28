"""Operators for large training-data pipelines: cleaning, filtering, deduplication,
tokenising, packing and scoring of document tables. Nothing else in the library
imports this subpackage."""
