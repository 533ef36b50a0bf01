"""Training-data operators on Spark DataFrames, and the queries that apply them.

Nothing else in the package imports this subpackage.
"""
