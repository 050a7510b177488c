"""Structured Streaming hand-over between layers."""
