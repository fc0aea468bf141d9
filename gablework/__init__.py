"""Spark-native analytics of building facades, and operators of a training-data pipeline."""
