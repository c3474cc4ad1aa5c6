"""Operators for preparing text corpora as training data; see README, section "Corpus operators"."""
