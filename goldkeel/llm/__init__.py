"""Operators for text and vector corpora that feed language-model training."""
