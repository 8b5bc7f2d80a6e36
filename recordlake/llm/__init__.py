"""Operators of a training-data pipeline over documents and web pages.

Nothing else in the library imports this package. ``queries`` registers one query per
operator; the operators themselves take any table and column names.
"""
