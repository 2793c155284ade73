"""Point-in-time analytics on Spark: bitemporal joins, panels, labels, features, evaluation and publication."""
