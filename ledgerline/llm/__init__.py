"""Operators of a training-data pipeline: one module for each, and their queries in `queries`."""
