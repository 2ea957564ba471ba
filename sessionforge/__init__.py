"""Event-time clickstream analytics on Spark."""
