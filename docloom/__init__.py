"""A PySpark-native engine for document analytics, retrieval and corpus preparation."""
