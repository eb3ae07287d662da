"""Corpus operators for training-data pipelines (deletable as a whole)."""
