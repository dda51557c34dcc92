"""Event-time analytics for sensor readings, written on the Spark DataFrame API."""

__version__ = "0.1.0"
