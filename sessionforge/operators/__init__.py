"""Batch operators: sessions, scoring, latency, partitions, upsert, generator."""
