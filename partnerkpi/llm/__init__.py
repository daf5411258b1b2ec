"""Operators of a training-data pipeline: near-duplicate search, language, tokens, quality, decontamination, LM scores.

Nothing outside this package imports it. Each operator is a module with a general interface; ``queries`` holds the thin
registered queries and their oracle SQL, ``/corpus_pipeline.py`` the five-stage pipeline.
"""
