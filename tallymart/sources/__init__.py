"""Readers, writers and the views that feed them."""
