"""Operators for preparing training text at scale.

Every operator takes and returns DataFrames; the thin queries over the given tables
are in ``queries``. Nothing else in the library imports this subpackage.
"""
