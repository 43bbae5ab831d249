"""Spark-native surveillance of sequenced bacterial isolates."""
