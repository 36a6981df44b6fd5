"""Triangle counting on edge lists and frequency statistics on integer streams, as Spark DataFrames."""

__version__ = "0.1.0"
