"""Operators of the reference programs, as DataFrame transformations."""
