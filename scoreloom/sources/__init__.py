"""Readers, writers and the entity tables built from star-schema data."""
