"""Span-quality analytics and training-data operators on Spark."""
