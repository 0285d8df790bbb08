"""Listing harvest and catalog engine on PySpark."""
