"""Operators for training-data pipelines (documents, conversations, embeddings).

Nothing else in the library imports this subpackage.
"""
