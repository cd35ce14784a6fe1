"""Spark-native catalog building and corpus operators."""
