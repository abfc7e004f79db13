"""ledgerlink: document dedup and record linkage as Spark DataFrame plans."""

__version__ = "0.1.0"
