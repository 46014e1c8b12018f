"""Iteration helper and the catalogue of registered queries."""
