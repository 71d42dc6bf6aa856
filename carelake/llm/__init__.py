"""Corpus operators for training-data preparation.

Each module holds one operator with its own general interface; ``queries`` holds the
registered queries.  Nothing else in the library imports this subpackage.
"""
