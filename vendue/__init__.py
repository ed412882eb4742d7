"""Retail analytics operators for Spark DataFrames."""
