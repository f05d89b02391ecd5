"""Readers and writers of the lake."""
