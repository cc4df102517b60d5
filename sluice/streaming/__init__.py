"""Arriving data."""
