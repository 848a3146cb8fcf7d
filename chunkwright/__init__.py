"""Spark-native building of verified, sharded fine-tuning datasets from text corpora."""
