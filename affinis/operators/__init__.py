"""Operators over ratings, sets, weights and predictions."""
