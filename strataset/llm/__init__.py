"""Operators for training-data pipelines, and their queries (`strataset.llm.queries`)."""
