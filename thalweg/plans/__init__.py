"""Registered queries over the test tables, and whole pipelines."""
