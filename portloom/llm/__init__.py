"""Operators for training-data pipelines; each works on a DataFrame and returns one."""
