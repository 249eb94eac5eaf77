"""Operators for preparing training data; see README.md, "Training data"."""
