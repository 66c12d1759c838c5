"""Readers, sinks, staging and fixed lookup tables."""
