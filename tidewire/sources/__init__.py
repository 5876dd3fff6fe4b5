"""Readers, writers and adapters for event tables and topic logs."""
