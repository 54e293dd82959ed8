"""Readers and writers of map files."""
