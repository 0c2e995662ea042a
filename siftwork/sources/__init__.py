"""Scans, sinks and report documents."""
