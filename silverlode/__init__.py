"""Batch retail analytics on Spark: bronze, silver and gold layers as DataFrame functions."""
