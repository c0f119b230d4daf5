"""Scans, sinks and table versions."""
