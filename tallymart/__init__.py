"""Retail lake pipeline and mart engine on PySpark DataFrames.

Layers: bronze (raw text) -> silver (typed, partitioned Parquet) -> gold
(monthly aggregates), with quarantine and audit beside them, and time-series
and customer marts on top.  Every operator takes and returns lazy DataFrames.
"""
