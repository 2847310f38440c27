"""Reorder analytics on Spark: tables in, features, scores and metrics out.

The package is a set of functions from DataFrames to DataFrames.  Reading and
writing live in ``sources``, column expressions in ``functions``, table
operators in ``operators``, composed jobs in ``plans`` and the continuous
scoring job in ``streaming``.
"""
