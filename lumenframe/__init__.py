"""Analytics operators over Spark DataFrames.

Every public operator takes DataFrames (plus plain parameters) and returns a
DataFrame, so jobs compose into one Catalyst plan.  See README.md for the map.
"""
