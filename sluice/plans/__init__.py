"""Whole flows: validation, promotion, the model lifecycle, triage, and the command line."""
