"""Connections to stores and brokers: specs, readers, writers."""
