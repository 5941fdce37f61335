"""Operators that prepare text, vectors and conversations for training language models."""
