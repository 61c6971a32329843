"""Operators for building training data from large text corpora."""
