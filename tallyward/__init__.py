"""Medical-claims reporting as plain Spark DataFrame functions.

Operators take DataFrames and parameters and return DataFrames; nothing is
executed until the caller acts on the result.  Exceptions are ranks, percentiles
and matrices, which materialise ordered or grouped rows first.
"""
