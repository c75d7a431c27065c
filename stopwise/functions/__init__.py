"""Scalar functions and time rules."""
