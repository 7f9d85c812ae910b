"""Fluvion: sources."""
