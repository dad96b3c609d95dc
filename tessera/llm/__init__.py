"""Operators of a training-data pipeline (tokenizing, classifiers, near-duplicates, search, scans).

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports it.
"""
