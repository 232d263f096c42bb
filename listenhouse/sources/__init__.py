"""Scans: topics, landed events, warehouse tables, the calendar."""
