"""Structured Streaming jobs: scoring, logging and drift monitoring."""
