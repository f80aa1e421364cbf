"""Readers, writers and message shapes."""
