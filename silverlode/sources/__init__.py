"""Readers and writers: CSV, rate payloads, JDBC and the layer tables."""
