"""Connection-log analytics on Spark."""
