"""Structured Streaming: parsing, 60-second sinks and an event-time twin of the bucket operator."""
