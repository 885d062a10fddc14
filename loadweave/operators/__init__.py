"""Relational, time-series, statistical and regression operators over DataFrames."""
