"""Hourly event-lakehouse operators for PySpark: every function takes and returns DataFrames."""
