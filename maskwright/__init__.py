"""A PySpark-native engine for building and auditing grounded image-text datasets."""
