"""Readers and writers of landed files and saved tables."""
