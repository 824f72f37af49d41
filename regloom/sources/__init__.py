"""Readers, writers, file inventory and archive expansion."""
