"""Operators that prepare text for training, each a plain function on DataFrames."""
