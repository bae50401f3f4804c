"""Listing analytics on Spark: raw portal records to ranked deals."""

__version__ = "0.1.0"
