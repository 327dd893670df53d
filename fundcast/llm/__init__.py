"""Operators for preparing language-model training data.

Nothing outside this package imports it, apart from ``corpus_pipeline.py`` and
the guarded registration in ``__spark_entry__.py``.
"""
