"""Operators for training-data pipelines over the tables documents, pages and benchmark."""
