"""Retail star-schema cleaning, loading and analytics on Spark DataFrames."""
