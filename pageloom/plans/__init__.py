"""Whole jobs: the staged pipeline and the registered queries."""
