"""Tick analytics for live trade feeds, written as PySpark DataFrame functions.

Every operator takes and returns DataFrames built from Spark's own expressions, so one function
serves a batch table and a stream alike.
"""
