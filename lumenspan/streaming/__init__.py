"""Spans as a stream."""
