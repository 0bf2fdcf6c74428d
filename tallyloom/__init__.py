"""Campaign and tabular wrangling on Spark.

Operators take and return DataFrames, functions take and return Columns, plans are whole jobs
composed from both.  Nothing here runs Python code per row.
"""
