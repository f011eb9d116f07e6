"""Operators over DataFrames: relational, episodes, sampling, features, matrices, models, metrics, graph."""
