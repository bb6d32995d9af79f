"""Inputs: a registry of sources, tables, JSON lines and shard sets."""
