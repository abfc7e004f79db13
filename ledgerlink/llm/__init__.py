"""Operators for preparing large text corpora: sharding, filters, dedup, mixing, scoring and token output."""
