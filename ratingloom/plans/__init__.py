"""Helpers that shape physical plans: skew-safe joins, checkpoint location, session settings."""
