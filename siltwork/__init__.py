"""Siltwork: layered warehouse loading and data quality on Spark.

Raw extracts settle through three layers. Bronze holds the extracts as they
came, silver holds cleansed and typed rows with lineage, gold holds the
conformed tables that reports join.
"""
