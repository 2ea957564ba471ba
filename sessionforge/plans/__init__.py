"""Compositions that answer a question about a run."""
