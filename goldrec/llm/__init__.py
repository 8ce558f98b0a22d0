"""Operators for preparing language-model training data, as Spark jobs.

Nothing outside this folder (but ``corpus_pipeline.py`` and the guarded import
in ``__spark_entry__.py``) depends on it.
"""
