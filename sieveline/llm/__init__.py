"""Operators for preparing training corpora: filtering, deduplication, packing.

Nothing outside this subpackage imports it. Every operator takes and returns
DataFrames and accepts whole tables; see the docstring of each module for the
method, the plan it makes and the defined result of edge cases.
"""
