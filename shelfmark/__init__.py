"""Retail order analytics on Spark: clean, validate, report, segment, score."""
