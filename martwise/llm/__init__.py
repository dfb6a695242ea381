"""Operators for preparing text, vectors and web pages as training data.

Each module holds one operator with its own general interface; ``queries``
registers a thin query per operator.  Nothing outside this package (and
``corpus_pipeline.py``) imports it.
"""
