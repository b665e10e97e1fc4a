"""Typed sources, landing jobs, sinks and state."""
