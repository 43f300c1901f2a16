"""Operators of a training-data pipeline over document tables.

Nothing else in the library imports this subpackage.  Every operator takes DataFrames and
column names, keeps only the columns it needs (extra or clashing names never matter), and
treats a null text as the empty text.
"""
