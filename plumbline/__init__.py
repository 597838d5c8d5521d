"""plumbline: a PySpark-native engine for streams of regulatory and news metadata."""
