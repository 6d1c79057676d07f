"""lakeline: an incremental bronze/silver/gold trip pipeline on Spark DataFrames."""

__version__ = "0.1.0"
