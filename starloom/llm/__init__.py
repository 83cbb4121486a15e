"""Operators of a training-data pipeline over tables of documents.

Documents are rows with ``doc_id`` (long) and ``text`` (string); other columns are carried or ignored as each operator says.
"""
