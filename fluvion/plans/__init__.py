"""Fluvion: plans."""
