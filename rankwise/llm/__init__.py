"""Operators of a training-data pipeline, each in a module of its own.

Nothing else in the library imports this subpackage; its queries are in
``rankwise.llm.queries``.
"""
