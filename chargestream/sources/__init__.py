"""Capture sources, record sinks, and captures derived from the test tables."""
