"""PySpark-native analytics for multi-rate recordings and text corpora."""
