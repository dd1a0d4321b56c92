"""Analytics over meeting records, votes and speeches, expressed as Spark plans."""

__version__ = "0.1.0"
