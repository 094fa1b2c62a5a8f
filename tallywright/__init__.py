"""Reconciliation, audit rules and financial reporting as Spark DataFrame jobs.

Every operator is a plain function from DataFrames to a DataFrame.  Sessions,
paths, dates and tolerances are arguments; nothing reads the clock by itself.
"""

__version__ = "0.1.0"
