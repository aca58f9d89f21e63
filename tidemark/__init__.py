"""tidemark: a PySpark-native engine that fingerprints, de-duplicates and screens large collections."""

__version__ = "0.1.0"
