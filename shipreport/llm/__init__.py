"""Operators that prepare text corpora for training, with their queries."""
