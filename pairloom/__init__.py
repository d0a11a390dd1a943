"""Spark-native preparation of image-edit training pairs."""
