"""Operators over spans: DataFrame in, DataFrame out."""
