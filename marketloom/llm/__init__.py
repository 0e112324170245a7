"""Operators that prepare training data for language models, by documents and URLs."""
