"""Operators of a training-data pipeline over ``documents``-like tables.

Nothing outside this package imports it. Each module holds one operator with
a general interface; ``queries.py`` derives the registered digest queries.
"""
