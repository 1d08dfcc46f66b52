"""Whole jobs: building training data, training, scoring a day, monitoring a day."""
