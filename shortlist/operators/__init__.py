"""Relational operators on grouped rows."""
