"""Operators of a training-data pipeline over documents, pages and embeddings.

Every operator is a module with its own general interface; ``queries`` registers
the ten ``opN_`` queries that apply them to the given tables.
"""
