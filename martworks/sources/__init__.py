"""Readers, writers and load state."""
