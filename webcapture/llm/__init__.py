"""Operators that prepare training data for language models, each built by one named method."""
