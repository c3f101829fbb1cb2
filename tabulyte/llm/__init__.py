"""Operators for training-data pipelines. Queries are registered in `queries`."""
