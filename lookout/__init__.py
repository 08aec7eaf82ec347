"""Spark-native curation of machine-learning datasets built from camera-image sequences."""
