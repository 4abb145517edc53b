"""Operators for training-data pipelines: each takes and returns DataFrames. Queries are in `llm.queries`."""
