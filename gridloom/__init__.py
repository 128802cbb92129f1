"""A Spark-native engine for gridded forecast data."""
