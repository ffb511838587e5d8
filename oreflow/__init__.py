"""Layered (bronze / silver / gold) data processing on Spark DataFrames."""
