"""Readers of stored report rows and of catalogue and content-site tables."""
