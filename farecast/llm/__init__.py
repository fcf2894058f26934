"""Operators for large-scale training-data pipelines.

Nothing else in the package imports this subpackage; its queries and their
SQL are in ``queries`` and ``oracle``.
"""
