"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage; its queries are in
``queries.py``, their DuckDB SQL in ``sql.py``.
"""
