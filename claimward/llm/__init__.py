"""Operators of a training-data pipeline over the tables documents, pages, benchmark and labels.

Nothing else in the package imports this subpackage. Every operator takes and returns
DataFrames; Python runs only inside tasks, over Arrow batches, and nothing that grows with
the corpus reaches the driver.
"""
