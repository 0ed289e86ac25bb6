"""Retail customer-360 on Spark: documents -> raw layer -> star-schema mart -> customer flags."""

__version__ = "0.1.0"
