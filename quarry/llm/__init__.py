"""Operators for large-scale training-data pipelines.

Each module holds one operator with a general interface (any id and text
column, parameters); ``queries`` registers the thin driver queries. Nothing
outside this subpackage imports it except the driver's entry module.
"""
