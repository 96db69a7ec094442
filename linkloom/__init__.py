"""A PySpark-native engine for web link-graph analytics."""
