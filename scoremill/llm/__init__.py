"""Operators for preparing training text, one module each; nothing else in the package imports them."""
