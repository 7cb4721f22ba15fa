"""Hierarchical demand forecasting written with the Spark DataFrame API."""
