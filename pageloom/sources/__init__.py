"""Readers for page dumps and saved results."""
