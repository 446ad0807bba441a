"""Transforms: DataFrames in, DataFrames out."""
