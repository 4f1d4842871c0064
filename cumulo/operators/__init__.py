"""Operators: functions from DataFrame to DataFrame, and the sinks."""
