"""Operators for preparing training data: ten document and vector operators.

Each module holds one operator with a general interface (``DataFrame`` in,
``DataFrame`` out); ``queries.py`` applies them to the stored tables.
Nothing outside this subpackage imports it.
"""
