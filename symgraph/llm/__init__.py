"""Operators on texts and vectors for training data; nothing outside imports this subpackage."""
