"""Operators for corpora of training text; nothing else in this package imports them."""
