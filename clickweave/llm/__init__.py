"""Operators of a training-data pipeline, each with its query ``opN_<name>``.

Nothing outside this package imports it.
"""
