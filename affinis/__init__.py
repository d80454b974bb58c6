"""Collaborative filtering and set similarity as Spark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame; the session belongs
to the caller.  See README.md for the operator list.
"""
