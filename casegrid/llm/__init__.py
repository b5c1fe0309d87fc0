"""Operators for building language-model training data.

Nothing outside this package imports it. Each module holds one operator with a
general interface; ``registry`` binds the ``opN_*`` queries to the given tables.
"""
