"""siftwell: a PySpark-native engine for web and company intelligence."""
