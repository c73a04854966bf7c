"""Operators of a training-data pipeline: deduplication, search, language, tokens, archives.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
