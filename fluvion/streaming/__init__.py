"""Fluvion: streaming."""
