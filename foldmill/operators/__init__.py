"""Operators: functions from DataFrames to DataFrames, and the fitted stages they use."""
