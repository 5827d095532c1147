"""Operators of a training-data pipeline: language spans, personal data, near
and exact duplicates, tokenisation, URL filters, mixing and quality rules.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it."""
