"""Operators of a training-data pipeline: one module per operator, each with its registered query.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
