"""Lakehouse operators for Spark, as plain functions over DataFrames."""
