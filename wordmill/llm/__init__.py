"""Operators for preparing language-model training data, as Spark jobs.

Nothing outside this folder (but for the guarded lookup in __spark_entry__.py and
corpus_pipeline.py) imports it.
"""
