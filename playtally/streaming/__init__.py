"""Structured Streaming jobs and the replay harness."""
