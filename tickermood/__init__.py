"""News sentiment and market moves as Spark DataFrame jobs."""

__version__ = "0.1.0"
