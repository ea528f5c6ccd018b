"""Readers, writers and the roles that tables play."""
