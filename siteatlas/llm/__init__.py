"""Operators of a training-data pipeline: text similarity, cleaning, formatting and mixing."""
