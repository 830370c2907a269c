"""PySpark-native analytics for large prose corpora."""
