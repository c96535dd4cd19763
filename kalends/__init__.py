"""Dimensional modelling and time intelligence on Spark DataFrames."""
