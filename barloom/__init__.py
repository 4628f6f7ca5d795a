"""Time-series feature, forecasting and calibration analytics on Spark DataFrames."""
