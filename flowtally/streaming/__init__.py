"""Incremental forms of counting and trimming."""
