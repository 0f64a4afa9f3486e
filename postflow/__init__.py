"""Batch and streaming analysis of short social posts on Spark DataFrames."""
