"""billforge: a Spark-native engine for legislative data."""
