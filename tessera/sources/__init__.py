"""Readers and sinks with the guards the reference lacks."""
