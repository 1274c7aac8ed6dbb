"""Operators of a training-data pipeline, one module each.

Nothing outside this subpackage imports it; `queries.py` registers the
queries, `__spark_entry__.py` adds them when the subpackage is present.
"""
