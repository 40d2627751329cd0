"""Operators of a training-data pipeline: scoring, near-dedup, decontamination,
secret scans, tokenising and the like. Nothing outside this package (and
``corpus_pipeline.py``) imports it."""
