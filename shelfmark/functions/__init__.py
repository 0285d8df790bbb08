"""Scalar column functions and the page parser."""
