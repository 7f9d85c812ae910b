"""Fluvion: operators."""
