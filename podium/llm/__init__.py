"""Operators on text and names for large text collections; nothing outside this package imports it."""
