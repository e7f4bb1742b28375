"""Operators for building training data, one module each, and their queries."""
