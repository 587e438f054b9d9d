"""Operators on text and match pairs for training data; nothing outside this subpackage imports it."""
