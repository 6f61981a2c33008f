"""Operators for large text-corpus preparation.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
