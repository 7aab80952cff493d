"""Claims-cost analytics as PySpark DataFrame and MLlib jobs."""

__version__ = "0.1.0"
