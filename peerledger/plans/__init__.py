"""Compositions of operators: the feature table and the training run."""
