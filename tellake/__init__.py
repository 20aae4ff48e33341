"""Telemetry preparation on Spark DataFrames."""
