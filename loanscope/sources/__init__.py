"""Readers, writers and the layered table store."""
