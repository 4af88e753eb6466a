"""Retail lakehouse operators on Spark DataFrames."""
