"""Loads driven by a stream."""
