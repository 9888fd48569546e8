"""Structured Streaming forms: stateful rules, late split, queries, sinks."""
