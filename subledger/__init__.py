"""Subscription and transaction analytics as Spark DataFrame transformations.

``sources``    scans, sinks and reference data (CSV, partitioned Parquet, dimension, id lists)
``functions``  column expressions: date parsing, text, rounding, null-safe ordering
``operators``  reusable relational steps: dedupe, merge, gaps, exclusion, key lookup
``plans``      whole jobs and reports built from the operators
``streaming``  the daily append as a micro-batch job
"""
