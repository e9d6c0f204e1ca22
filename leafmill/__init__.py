"""leafmill: document extraction and corpus analytics as PySpark DataFrame operations."""

__version__ = "0.1.0"
