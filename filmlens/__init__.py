"""Catalog-and-ratings analytics on PySpark DataFrames."""
