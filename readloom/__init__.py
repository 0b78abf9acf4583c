"""Genomics read analytics on PySpark: DataFrame in, DataFrame out."""
