"""Gated model lifecycle, triage and corpus preparation on Spark."""
