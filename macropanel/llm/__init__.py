"""Operators of a large-scale training-data pipeline over the tables documents, embeddings, pages and conversations.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it. ``catalog.py`` registers one query
per operator; each operator module has a general interface of its own.
"""
