"""Operators for training data: fingerprints, near-duplicates, mixing, classifiers, tokens, URL rules."""
