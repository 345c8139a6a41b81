"""Operators that prepare training data for language models.

Every operator takes and returns DataFrames. Nothing else in the library
imports this subpackage; its queries are in ``queries.py``.
"""
