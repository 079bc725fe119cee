"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Its queries are in
``queries``; this file imports nothing, so that a worker which needs one operator
loads only that one.
"""
