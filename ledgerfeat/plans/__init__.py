"""Whole jobs: the feature table, model training, search and scoring."""
