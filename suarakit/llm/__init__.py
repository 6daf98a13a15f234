"""Operators for building training data: archives, fingerprints, filters, scores and mixes."""
