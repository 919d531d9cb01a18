"""Structured Streaming service: request messages in, replies out."""
