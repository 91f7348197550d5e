"""Operators for preparing text corpora at scale; nothing outside this package imports it."""
