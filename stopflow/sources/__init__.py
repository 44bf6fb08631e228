"""Readers, writers and the views derived from the benchmark tables."""
