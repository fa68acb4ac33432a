"""Operators for preparing training text: mixing, scoring, filtering, dedup, formatting.

Every module holds one operator with its own interface; ``catalog`` registers one query per
operator over the test tables. Nothing outside this package imports it.
"""
