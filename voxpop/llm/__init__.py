"""Operators for large-scale training-data pipelines.

Thirteen operators over ``documents``, ``pages``, ``embeddings``, ``benchmark``,
``labels`` and ``conversations``; ``queries.QUERIES`` and ``queries.ORACLE`` hold
the named queries and their SQL.  Nothing else in the library imports this
subpackage.
"""
