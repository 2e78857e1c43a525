"""Operators for large-scale training-data preparation.

Each module holds one operator with its own general interface; ``catalog``
registers the thin ``opN_<name>`` queries.  Nothing else in the library
imports this subpackage.
"""
