"""Operators: plain functions from DataFrame to DataFrame, for batch and (where they keep no state)
streaming input, and Spark ML stages."""
