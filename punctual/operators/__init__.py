"""Operators: functions from DataFrames to DataFrames, without input, output or actions."""
