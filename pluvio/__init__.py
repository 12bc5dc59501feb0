"""Gridded rainfall monitoring, seasonal forecasting and corpus preparation on Spark DataFrames."""
