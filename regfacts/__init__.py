"""Regulatory disclosure facts on Spark."""
