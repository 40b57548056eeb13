"""Readers, seeded dimensions and table sinks."""
