"""Operators over text and vector tables for preparing training data.

Nothing outside this folder imports it. Each module holds one operator with its own interface;
``queries.py`` derives the registered queries from them and ``oracles.py`` their SQL.
"""
