"""Readers, writers and the stored vector collection."""
