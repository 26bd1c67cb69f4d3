"""Genome-catalogue analytics on Spark DataFrames."""
