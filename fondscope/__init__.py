"""Catalogue attribute analytics on Spark: every operation is a function from DataFrames to DataFrames."""
