"""Readers, writers and the test-data adapter."""
