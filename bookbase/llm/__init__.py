"""Operators for preparing training data, each by one named method; see the README."""
