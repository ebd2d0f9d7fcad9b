"""Compositions a user runs end to end."""
