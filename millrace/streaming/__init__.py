"""Streaming twins of the operators that keep state."""
