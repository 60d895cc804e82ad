"""Operators: functions from DataFrames to DataFrames, keyed by run or source."""
