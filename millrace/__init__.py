"""Retail warehouse operators for Spark: every operator takes and returns DataFrames."""
