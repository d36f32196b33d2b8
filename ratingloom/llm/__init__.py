"""Operators of a training-data pipeline over documents, conversations and vectors.

Nothing else in the library imports this subpackage. ``queries`` applies each operator to its
whole table.
"""
