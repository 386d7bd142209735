"""The business queries."""
