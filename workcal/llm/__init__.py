"""Operators for preparing training text, each by its own method.

Nothing else in the library imports this subpackage.
"""
