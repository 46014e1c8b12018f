"""Readers, writers and the test-table derivations."""
