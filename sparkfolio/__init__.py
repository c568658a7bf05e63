"""PySpark-native analytics over provenance-preserving document records."""
