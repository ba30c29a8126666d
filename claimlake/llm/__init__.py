"""Operators of a training-data pipeline: one module per operator, all on DataFrames.

``queries.QUERIES`` registers one query per operator; ``oracle.ORACLE`` holds the DuckDB SQL of
those that SQL can express. Nothing outside this subpackage imports it.
"""
