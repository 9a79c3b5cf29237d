"""Spark-native data quality and medallion engine.

Rules are declared per entity and run as DataFrame plans; see README.md.
"""
