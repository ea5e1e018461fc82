"""Operators for training-data pipelines.

Nothing outside this subpackage imports it.  Its queries and oracle SQL live in
``spanloom.llm.queries``.
"""
