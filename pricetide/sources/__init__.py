"""Readers: landed API responses and snapshot tables."""
