"""Operators for training-data pipelines: one module per operator, the
registered queries in ``registry``.  Nothing outside this package (and
``corpus_pipeline.py``) imports it."""
