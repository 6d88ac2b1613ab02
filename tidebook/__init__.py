"""tidebook: Spark-native processing of ordered market events."""
