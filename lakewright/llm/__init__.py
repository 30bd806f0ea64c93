"""Operators that a large-scale training-data pipeline needs.

Nothing outside this subpackage imports it. Each operator module states, in
its docstring, what it does with nulls, empty and very long texts, ties,
repeated rows, empty tables and clashing column names.
"""
