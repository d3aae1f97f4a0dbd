"""Operators and queries for preparing text corpora to train language models."""
