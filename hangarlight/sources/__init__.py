"""Readers of the registry, listing, filing and licence formats."""
