"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. ``queries`` and
``oracle_sql`` list the registered queries.
"""
