"""Spark-native analytics over recorded sensor logs and the datasets made from them."""
