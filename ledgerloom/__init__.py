"""ledgerloom: a PySpark-native engine for payments data.

Every operator is a pure function over DataFrames or Columns: run dates are
parameters, no RDDs, no Python row UDFs, no driver-side row loops.
"""
