"""Readers, writers and adapters."""
