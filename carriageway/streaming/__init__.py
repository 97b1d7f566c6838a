"""Structured Streaming jobs: bronze, silver with expectations, windows, gold."""
