"""Structured Streaming: stamping hashes when rows arrive."""
