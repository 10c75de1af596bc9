"""Operators of a training-data pipeline: filters, tokenizers, joins, dedup, formatting, sharding.

Nothing else in ``boxloom`` imports this subpackage.
"""
