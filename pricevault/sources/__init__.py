"""Scans and sinks: raw files, tables, landing zone and batch logs."""
