"""Retail medallion engine: plain functions from DataFrames to DataFrames."""
