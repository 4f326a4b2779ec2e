"""gridmart: layered-lake analytics on Spark DataFrames.

Subpackages
-----------
functions  Column expressions (shares, flags, classifications, scoring formulas).
operators  DataFrame -> DataFrame operators (dedupe, grids, shares, tiers, gaps, as-of, ...).
sources    Readers and writers (driver tables, partitioned lake datasets, drift-tolerant reads).
plans      Marts and the registered driver queries built from the operators.
streaming  Incremental promotion as a Structured Streaming job.
"""

__version__ = "0.1.0"
