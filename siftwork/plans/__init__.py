"""Assembled flows: preparation, training, evaluation."""
