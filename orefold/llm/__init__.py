"""Operators for preparing training text at scale.

Nothing else in the library imports this subpackage. ``queries.py`` has the
registered queries of the ten operators.
"""
