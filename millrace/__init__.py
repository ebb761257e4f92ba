"""Spark-native medallion analytics: raw feeds in, checked and summarised tables out.

Everything is DataFrame / Spark SQL / Structured Streaming; no Python UDFs.
"""
