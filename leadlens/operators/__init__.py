"""Data-parallel operators: each takes and returns DataFrames and stays inside Spark."""
