"""Scoring of delimited records in batch and in streams, on Spark."""
