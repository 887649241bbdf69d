"""Continuous feeding of the append-only event log."""
