"""Relational operators of the resolution engine."""
