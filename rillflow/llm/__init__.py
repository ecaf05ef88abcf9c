"""Operators for preparing language-model training text.

Nothing else in the library imports this subpackage; it can be removed as a
whole.  ``queries.QUERIES`` and ``queries.ORACLE_SQL`` hold what the entry
module registers.
"""
