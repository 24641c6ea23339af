"""Corpus-quality analytics on Spark DataFrames."""
