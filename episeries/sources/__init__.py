"""Readers, writers and the layouts they use."""
