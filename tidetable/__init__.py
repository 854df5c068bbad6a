"""A Spark-native engine for service-reliability data: temporal joins, histories, deduplication, late data, roll-ups."""
