"""Operators of a training-data pipeline; see the README's list of methods."""
