"""Operators of a training-data pipeline (token counts, sharding, dedup, packing, search, scoring).

Nothing outside this folder and ``corpus_pipeline.py`` imports it.
"""
