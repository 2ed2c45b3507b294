"""Quarryline: a PySpark-native analytics engine for crawled company data."""
