"""Operators on edge tables: DataFrame in, DataFrame out."""
