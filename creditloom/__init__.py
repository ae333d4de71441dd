"""Spark-native credit-risk analytics: clean, label, featurise, train, score, monitor."""
