"""Structured Streaming wiring and the versioned entity tables it maintains."""
