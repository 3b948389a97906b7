"""Analytic jobs over event tables. Inputs are DataFrames with the column names stated per job."""
