"""Clickstream analytics as plain DataFrame functions.

Every transform takes DataFrames and parameters and returns a DataFrame, so
the same function serves a batch table and a stream. Nothing here keeps state,
changes session settings or brings rows to the driver.
"""
