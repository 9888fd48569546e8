"""Operators of a training-data pipeline over the ``documents`` and ``pages`` tables.

One module per operator; ``queries.py`` registers one query for each. Nothing
outside this package (and ``corpus_pipeline.py``) imports it.
"""
