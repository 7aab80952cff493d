"""Operators on claims tables, each a DataFrame in and a DataFrame out."""
