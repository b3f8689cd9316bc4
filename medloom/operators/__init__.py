"""Operators on clinical tables, as functions of DataFrames."""
