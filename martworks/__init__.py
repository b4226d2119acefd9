"""Retail lake and mart engine on PySpark DataFrames."""
