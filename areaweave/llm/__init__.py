"""Operators for preparing training data: extraction, rules, deduplication, packing, archives, models."""
