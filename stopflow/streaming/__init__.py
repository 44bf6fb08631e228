"""Incremental refresh of validations and features."""
