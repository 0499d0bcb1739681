"""Operators for preparing training data from documents. Nothing else in the library imports them."""
