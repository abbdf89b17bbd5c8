"""Operators for preparing training text, and the queries that apply them.

Nothing outside this package imports it.
"""
