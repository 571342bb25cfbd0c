"""Structured Streaming forms of the detection dataflow."""
