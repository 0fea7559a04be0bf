"""Operators and a pipeline for training data: one module an operator, queries in ``queries``."""
