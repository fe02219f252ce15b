"""Spark-native chain extraction, identity resolution and evidence analysis.

Every operator is a function from DataFrames (and parameters) to a DataFrame.
Nothing here holds data on the driver; Catalyst plans every step.
"""
