"""Operators for cleaning, scoring and encoding training text."""
