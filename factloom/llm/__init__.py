"""Operators of a training-data pipeline, one module each.

Nothing outside this folder and ``corpus_pipeline.py`` imports it.
"""
