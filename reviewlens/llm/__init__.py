"""Operators for large text corpora: cleaning, scoring, joining, packing.

Nothing else in the library imports this package.  Operators take and return
DataFrames; functions that run inside tasks work on Arrow batches with numpy.
"""
