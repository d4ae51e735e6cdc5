"""Readers, writers and the feeds derived from the order tables."""
