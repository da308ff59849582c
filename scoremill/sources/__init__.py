"""Stores that are read and sinks that are written."""
