"""folioforge: a PySpark-native engine for archived web content."""

__version__ = "0.1.0"
