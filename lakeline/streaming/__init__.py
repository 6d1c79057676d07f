"""Structured Streaming front end for landing zones with immutable file names."""
