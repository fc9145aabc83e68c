"""Motorlake: a Spark-native lakehouse for classified car listings."""
