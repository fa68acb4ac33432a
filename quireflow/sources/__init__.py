"""Readers, writers, tables and the keyed feature store."""
