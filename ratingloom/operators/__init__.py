"""User-level operators: lazy functions from DataFrames to a DataFrame.

Column names and thresholds are keyword parameters. Wherever a top-k or an argmax is taken, the
key is the last sort column, so ties give the same rows on every run.
"""
