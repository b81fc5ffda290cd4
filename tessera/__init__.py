"""Spark-first engine for multilingual, multi-market product data."""
