"""Operators for large-scale training-data pipelines.

Each module holds one operator with its own general interface; ``queries``
derives the registered ``opN_*`` rows from them.  Nothing else in the library
imports this subpackage.
"""
