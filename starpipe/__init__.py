"""Batch pipeline from project-management tables to a star schema, on PySpark DataFrames."""
