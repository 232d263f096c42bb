"""Batch sinks and load modes."""
