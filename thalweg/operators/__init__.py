"""Operators over links, catchments, lakes and cells."""
