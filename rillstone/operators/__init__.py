"""Operators over whole tables: DataFrame in, DataFrame out."""
