"""Structured Streaming form of the layered pipeline."""
