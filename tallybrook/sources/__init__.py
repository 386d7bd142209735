"""Readers, the changelog store and file helpers."""
