"""tidewatt: electricity-market time series on Spark DataFrames."""
