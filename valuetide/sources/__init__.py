"""Schemas, readers, writers and the role adapters for the star-schema tables."""
