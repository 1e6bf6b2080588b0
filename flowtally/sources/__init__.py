"""Inputs, outputs and the answer cache."""
