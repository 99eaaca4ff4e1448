"""Operators for preparing training data; see README for the methods and their figures."""
