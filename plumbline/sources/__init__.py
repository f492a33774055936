"""Readers: every source is an explicit-schema DataFrame."""
