"""Operators for large training-data corpora, and their registered queries.

Nothing else in the library imports this subpackage.
"""
