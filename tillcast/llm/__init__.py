"""Operators for training-data pipelines on text, pages, conversations and vectors."""
