"""Operators for building training corpora from text tables."""
