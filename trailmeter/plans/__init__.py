"""Pipelines. Each takes and returns DataFrames and covers a range of days in one job."""
