"""Curating repeated, wide, all-text observations into a validated relational model on Spark.

Everything is a DataFrame -> DataFrame function with the column names as
parameters; see the README for the map of modules.
"""
