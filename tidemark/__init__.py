"""Order-event ingest and analytics on Spark: validated merge, dead letters, serving queries."""

__version__ = "0.1.0"
