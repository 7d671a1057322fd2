"""Operators for preparing language-model training data, and their registered queries.

Nothing else in the library imports this subpackage.
"""
