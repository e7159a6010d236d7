"""Reusable steps from DataFrames to a DataFrame."""
