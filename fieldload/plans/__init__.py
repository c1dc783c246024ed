"""Composite plans: import, purge, publish."""
