"""Operators for training-data pipelines over large text and vector tables."""
