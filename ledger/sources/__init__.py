"""Readers and writers of the source tables and the file lake."""
