"""Operators for building language-model training data, each with its query over whole tables."""
