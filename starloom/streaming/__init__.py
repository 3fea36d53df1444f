"""Loads fed by a stream."""
