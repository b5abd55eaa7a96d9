"""Readers, warehouse layout and sinks."""
