"""Wardline: cohort, interval, time-series and feature operators on Spark DataFrames."""
