"""foliate: a PySpark engine for document collections and training-data preparation."""

__version__ = "0.1.0"
