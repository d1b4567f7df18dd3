"""Readers, platform mappings and sinks."""
