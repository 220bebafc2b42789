"""Whole jobs: read stage tables, call operators, write stage tables."""
