"""Incremental form of the stateless bronze step."""
