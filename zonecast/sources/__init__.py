"""Readers, writers and entity adapters."""
