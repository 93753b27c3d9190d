"""Operators for preparing training corpora: rules, archives, deduplication, models, packing."""
