"""Readers and writers, and raw stand-in tables derived from the test data."""
