"""Operators for pipelines of training data. Nothing outside this package imports it but the entry file."""
