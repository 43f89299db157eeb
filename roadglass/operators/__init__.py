"""Operators on DataFrames: time series, spatial, relational, reports, solver."""
