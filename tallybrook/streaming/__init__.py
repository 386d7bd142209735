"""Continuous ingestion and continuous state."""
