"""PySpark-native analytics for review and rating data."""
