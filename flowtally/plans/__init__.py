"""Declared pipelines."""
