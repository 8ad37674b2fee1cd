"""A Spark-native analytics engine for rated venues."""
