"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage.  Each module holds one
operator (general interface) plus the thin ``opN_*`` query that derives the
contract's digest columns from it; ``queries.py`` lists them all.
"""
