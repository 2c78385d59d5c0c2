"""Operators for preparing training text: cleaning, deduplication, mixing and encoding of documents.

Nothing outside this folder imports it.  Every operator takes a DataFrame with ``doc_id`` and ``text``
(other columns are ignored unless an operator names them, so extra columns may carry any name).
"""
