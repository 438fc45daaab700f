"""Operators for building training data from large document collections.

Every module holds one operator with its own general interface; ``queries`` applies them to the given tables.
"""
