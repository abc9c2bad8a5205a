"""Ledger conformance, quality profiling, grouping and rule-driven analysis on Spark DataFrames."""
