"""Operators for preparing large training corpora.

Nothing else in the library imports this subpackage.  ``queries`` holds the
registered queries, each operator has a module of its own.
"""
