"""Readers of source inputs, and sinks."""
