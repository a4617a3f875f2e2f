"""Operators for training-data pipelines over text tables.

Nothing outside this package imports it. ``queries`` holds the registered
queries and their SQL; every other module is one operator or a helper.
"""
