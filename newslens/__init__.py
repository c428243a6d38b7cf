"""newslens: news-corpus and media-sentiment analytics on Spark DataFrames."""

__version__ = "0.1.0"
