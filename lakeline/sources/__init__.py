"""Readers: landing files, lookups and the lineitem-derived trips fixture."""
