"""Canonical views, the query catalogue with its oracle, and whole jobs."""
