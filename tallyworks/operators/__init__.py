"""Operators: functions from DataFrame to DataFrame, free of actions unless they say so."""
