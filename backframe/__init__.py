"""Trailing-window features and pairwise feature analysis on Spark DataFrames."""
