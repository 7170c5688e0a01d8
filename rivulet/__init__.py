"""Change-data operators for Spark: envelopes, gates, appliers and progress."""

__version__ = "0.1.0"
