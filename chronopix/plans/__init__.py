"""Registered queries, each bound to its tables."""
