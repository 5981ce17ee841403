"""Readers and writers: topic log, JSON log lines, entity tables derived from the sample tables."""
