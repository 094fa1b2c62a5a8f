"""Readers, writers, the store catalogue and the binding to the given tables."""
