"""Spark-native analytics for listening-event streams.

Ingest JSON user events, repair their text, land them partitioned, build the
user / artist / song / location / session / calendar dimensions and the
listening fact table, and load them incrementally.
"""
