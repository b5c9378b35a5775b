"""Operators for preparing training data, one module each; ``queries`` registers one query per operator.

Nothing else in the package imports this one.
"""
