"""Sensor-track analytics on Spark DataFrames."""
