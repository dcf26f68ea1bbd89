"""Operators a training-data pipeline needs, on documents and embeddings.

Each module holds one operator with its own interface; ``queries`` registers
one query per operator over the given tables.
"""
