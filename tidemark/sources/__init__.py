"""Scans, sinks and streams."""
