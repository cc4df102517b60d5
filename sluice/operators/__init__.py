"""Operators on DataFrames: checks, statistics, sampling, profiles and models."""
