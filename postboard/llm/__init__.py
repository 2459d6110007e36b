"""Operators for preparing training data: filtering, deduplication, tokenising and packing.

Nothing outside this subpackage imports it.
"""
