"""Spark-native retail medallion analytics: ingest, clean, check, model and report."""
