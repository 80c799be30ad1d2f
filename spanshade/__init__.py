"""spanshade: PII detection and redaction as Spark DataFrame jobs."""

__version__ = "0.1.0"
