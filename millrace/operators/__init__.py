"""Relation-level operators: pure functions from DataFrames to DataFrames."""
