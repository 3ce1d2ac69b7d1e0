"""siftwell: curation and audit of training data on Spark."""

__version__ = "0.1.0"
