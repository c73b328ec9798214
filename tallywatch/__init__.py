"""Card-transaction analytics on Spark: contract, aggregates, features, scoring and monitoring."""

from tallywatch.config import Settings

__all__ = ["Settings"]
