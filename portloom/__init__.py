"""Spark-native medallion analytics: landing, cleaning, history, topology, marts and checks."""
