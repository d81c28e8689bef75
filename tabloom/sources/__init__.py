"""Readers, writers and the run registry."""
