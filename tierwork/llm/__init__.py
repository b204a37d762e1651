"""Operators of a training-data pipeline: documents, pages, vectors, conversations.

Nothing outside this subpackage imports it.
"""
