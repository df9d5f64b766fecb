"""Operators: DataFrame in, DataFrame out, lazy unless a staging area is passed."""
