"""Structured Streaming forms of discovery, pacing and cleaning."""
