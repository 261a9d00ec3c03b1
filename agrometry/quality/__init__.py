"""Declarative data-quality rules, compiled into one aggregation."""
