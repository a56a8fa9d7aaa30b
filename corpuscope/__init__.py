"""Labelled-text analytics on Spark: clean, profile, split, mine terms, classify.

Everything is a plain function from DataFrame to DataFrame. The library holds no
session; it takes the one behind the frame it is given.
"""
