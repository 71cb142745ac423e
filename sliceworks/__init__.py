"""Spark-native analytics of labelled volumes, and operators of a training-data pipeline."""
