"""Deterministic change logs of bibliographic facts on Spark DataFrames."""

__version__ = "0.1.0"
