"""Spark-native engine for site registers, footprint matching and gridded time series."""
