"""Origin-destination demand analytics and forecasting on Spark DataFrames."""
