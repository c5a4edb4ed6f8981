"""Operators for training-data pipelines over the corpus tables.

Each module holds one operator with a general interface (DataFrame in, DataFrame
out); ``registry`` binds them to the driver's tables. Nothing outside this folder
imports it.
"""
