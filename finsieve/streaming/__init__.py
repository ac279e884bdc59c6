"""Structured Streaming jobs and monitoring policies."""
