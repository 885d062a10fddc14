"""Structured Streaming forms of the hourly rollup."""
