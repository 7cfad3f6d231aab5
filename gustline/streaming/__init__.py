"""Streaming flows built from the same operators as the batch side."""
