"""Operators for preparing training text and vectors, each a function from DataFrames to a DataFrame.

Nothing else in the library imports this package.
"""
