"""Tabular data preparation and multi-class classification on Spark DataFrames."""

__version__ = "0.1.0"
