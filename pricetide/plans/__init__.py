"""Runs that read one layer and write the next."""
