"""Public-spending analytics on Spark: text extracts, star schema, marts and answers."""

__version__ = "0.1.0"
