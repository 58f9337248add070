"""millrace: a Spark-native analytics engine for a manufacturing supply chain."""
