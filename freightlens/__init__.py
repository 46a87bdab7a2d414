"""Logistics control-tower and freight-audit analytics on Spark DataFrames."""
