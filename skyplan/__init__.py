"""Observation-planning analytics over Spark DataFrames."""
