"""Distributed model jobs on MLlib and grouped aggregates."""
