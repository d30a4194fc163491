"""Relational operators over DataFrames (activity, merge, stats, sampling, ranking)."""
