"""Inventory and turnover analytics on Spark DataFrames."""
