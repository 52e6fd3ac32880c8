"""Operators of a training-data pipeline over ``documents``, ``pages`` and
``benchmark`` tables.

Nothing else in the library imports this subpackage.  Every operator takes and
returns DataFrames; :mod:`kindred.llm.registry` wraps each of them in the thin
query that the driver runs.
"""
