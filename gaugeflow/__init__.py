"""Keyed sensor readings on Spark: publish, stream, flag, store and summarise."""
