"""Readers, writers and document flatteners."""
