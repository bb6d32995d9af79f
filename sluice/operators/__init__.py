"""Operators over DataFrames: stages, cuts, splits, ranks, mixtures, statistics and sinks."""
