"""Structured Streaming counterpart of the nightly delta load."""
