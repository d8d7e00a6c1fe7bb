"""Structured Streaming jobs: the same operators, streaming sources and sinks."""
