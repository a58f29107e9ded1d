"""Operators for large-scale training-data pipelines.

Nothing outside this package, ``corpus_pipeline.py`` and ``tests/llm`` imports it.
"""
