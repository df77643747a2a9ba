"""Spark jobs over corpora of per-frame motion data, and over training text (subpackage llm)."""
