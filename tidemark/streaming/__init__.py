"""Structured Streaming assembly: watermarked windowed jobs and their sinks."""
