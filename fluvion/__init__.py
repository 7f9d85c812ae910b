"""Fluvion: multi-source observation analytics expressed in PySpark DataFrames."""

__version__ = "0.1.0"
