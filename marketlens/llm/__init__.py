"""Operators of a training-data pipeline over document and vector tables.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
``queries.QUERIES`` maps query names to ``(spark, sf_dir) -> DataFrame``.
"""
