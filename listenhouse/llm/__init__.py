"""Operators for large training-data pipelines.

Nothing outside this subpackage imports it; the top-level query registry adds
its queries only where it is present.
"""
