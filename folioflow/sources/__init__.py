"""Readers and writers with explicit schemas; nothing is inferred."""
