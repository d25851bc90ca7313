"""Operators of a training-data pipeline.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own general interface; ``queries`` registers the thin
``opN_*`` queries over the given tables.
"""
