"""Relational and image operators over DataFrames."""
