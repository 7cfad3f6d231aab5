"""Operators: pure functions from frame to frame."""
