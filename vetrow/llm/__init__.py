"""Operators of a training-data pipeline over documents and embeddings.

Every module holds one operator with a general DataFrame interface; ``queries``
binds them to the shared tables. Nothing else in the library imports this
subpackage.
"""
